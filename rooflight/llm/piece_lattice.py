"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units: a run without white space with the space before it, or a white-space
character, and no cut where some piece has the two characters side by side (``;`` and a carriage
return). Units are cut on into cells, between two characters that no piece of the unit can span: their
pair is no piece, and no piece has them with the character before or after. No lattice edge crosses
such a cut, so cells can be solved one by one. The rare cell of more than ``MAX_CELL`` characters is
solved once by a plain loop and cut where its best way passes, which leaves that way the best one. For every
distinct cell, all substrings up to the length of the longest piece are exploded and equi-joined with
the piece table; the matches are the edges of the cell's lattice. Grouped by cell, a fold with the
higher-order function ``aggregate`` keeps the best-scored way to every position (Viterbi), another one
walks back. A character without a piece becomes the pieces of its UTF-8 bytes.

Units are numbered within chunks of texts, cells within chunks of units, and the pieces of cells
return to the chunks, so that a cell travels once per chunk and not once per occurrence. The only
thing broadcast is the piece table, whose size is that of the tokenizer's file.

The segmentation is the one of largest summed piece score. A BPE model's own encoder merges pairs
by rank instead, so that ids may differ from it, whereas decoding always gives the text.

Edge cases: null or empty texts have no pieces and decode to empty text; a literal U+2581 is encoded
by its bytes, so that it comes back; repeated rows are encoded each; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooflight.llm.packing import CHUNK_TOKENS, chunk_id, expand, squeeze

#: A use of a cell is chunk << CELL_BITS | place in the chunk: room for 2^25 tasks of 2^12 chunks.
CELL_BITS = 26

MAX_CELL = 96
MARK = "▁"
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_PACK_ROWS = 400_000
_SLICE_BYTES = 4 << 20
_BLOCK_UNITS = 1 << 15  # units cut into cells at once


class Pieces:
    """A tokenizer file's pieces: ids, texts (a space for the mark), scores, and the ids of single bytes."""

    def __init__(self, model_file: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.rows, self.byte_ids, self.data = [], [m.unk_id()] * 256, []
        for i in range(m.get_piece_size()):
            piece, score = m.id_to_piece(i), m.get_score(i)
            if m.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.data.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                self.data.append(b"")
            else:
                text = piece.replace(MARK, " ")
                self.data.append(text.encode())
                self.rows.append((text, i, float(score)))
        #: Each character given as bytes costs ten more than the worst piece that is in use.
        self.fallback = min(s for _, _, s in self.rows if s > -1e8) - 10
        # A piece that costs more than the bytes of its characters is in no best way.
        self.rows = [r for r in self.rows if r[2] >= len(r[0]) * self.fallback]
        self.longest = max(len(t) for t, _, _ in self.rows)
        self.unit = _unit({t for t, _, _ in self.rows})
        texts = {t for t, _, _ in self.rows}
        self.pairs = _codes({t for t in texts if len(t) == 2})
        self.triples = _codes({t[i : i + 3] for t in texts for i in range(len(t) - 2)})

    def table(self, spark: SparkSession) -> DataFrame:
        return F.broadcast(spark.createDataFrame([*self.rows, ("", -1, 0.0)], "piece string, id int, score double"))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _unit(texts: set[str]) -> str:
    """The pattern of a unit; characters beyond ASCII count as one where they stand beside white space."""

    def kind(c: str) -> str:
        return re.escape(c) if c.isascii() else "[^\\x00-\\x7F]"

    side = {(kind(t[i]), kind(t[i + 1])) for t in texts for i in range(len(t) - 1) if _BLANK.match(t[i + 1]) or re.match(r"[\t-\r]", t[i])}
    joined = "".join(f"|(?<={a}){b}" for a, b in sorted(side))
    return rf"(?s:.)(?:(?<=[^\x09-\x0D])[^\x20\x09-\x0D]{joined})*"


@cache
def _joined(unit: re.Pattern) -> np.ndarray:
    """[x, y]: is there no cut between bytes x and y, one of them white space?"""
    seen = [chr(i) for i in range(128)] + ["é"] * 128
    out = np.zeros((256, 256), bool)
    for a in range(256):
        for b in range(256):
            if _BLANK.match(seen[b]) or _BLANK.match(seen[a]):
                out[a, b] = unit.fullmatch(seen[a] + seen[b]) is not None
    return out


def short_cells(cut: pa.StringArray, counts: np.ndarray, table: dict, longest: int, fallback: float) -> tuple[pa.StringArray, np.ndarray]:
    """Cells and their number by unit, cells of more than MAX_CELL characters cut where their best way passes."""
    long = np.flatnonzero(pc.utf8_length(cut).to_numpy() > MAX_CELL)
    if not len(long):
        return cut, counts
    arrays, done, number = [], 0, np.ones(len(cut), np.int64)
    for i in long.tolist():
        parts = _parts(cut[i].as_py(), table, longest, fallback)
        arrays += [cut.slice(done, i - done), pa.array(parts, pa.string())]
        number[i], done = len(parts), i + 1
    return pa.concat_arrays([*arrays, cut.slice(done)]), np.add.reduceat(number, np.cumsum(counts) - counts)


def _parts(cell: str, table: dict, longest: int, fallback: float) -> list[str]:
    best, back = array("d", [0.0]), array("q", [0])
    for i in range(1, len(cell) + 1):
        top, at = best[i - 1] + fallback, i - 1
        for a in range(max(0, i - longest), i):
            s = table.get(cell[a:i])
            if s is not None and (best[a] + s, a) >= (top, at):
                top, at = best[a] + s, a
        best.append(top)
        back.append(at)
    out, end, i = [], len(cell), len(cell)
    while i:
        if end - back[i] > MAX_CELL:
            out.append(cell[i:end])
            end = i
        i = back[i]
    return [cell[:end], *reversed(out)]


def _codes(texts: set[str]) -> np.ndarray:
    """Texts of up to three characters as sorted numbers."""
    return np.array(sorted(_code(*map(ord, t)) for t in texts) or [-1], np.int64)


def _code(first, *others):
    for c in others:
        first = first << 21 | c
    return first


def _among(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def cells(words: pa.StringArray, pairs: np.ndarray, triples: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The cells of units, one unit's after the other's, and how many each unit has."""
    if not len(words):
        return pa.array([], pa.string()), np.empty(0, np.int64)
    offsets, data = _buffers(words)
    c = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    place = np.concatenate([[0], np.cumsum(1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000))])  # of characters in the bytes
    ends = np.searchsorted(place, offsets[1:])
    border = np.zeros(len(c) + 1, bool)  # border[i]: do units part before character i?
    border[0] = border[ends] = True
    at = 1 + np.flatnonzero(~_among(_code(c[:-1], c[1:]), pairs) & ~border[1:-1])
    for left in (2, 1):  # triples with so many characters before the cut
        inside = (at >= left) & (at + 3 - left <= len(c))
        first = np.where(inside, at - left, 0)
        inside &= ~border[np.where(inside, first + 1, 0)] & ~border[np.where(inside, first + 2, 0)]
        at = at[~(inside & _among(_code(c[first], c[np.minimum(first + 1, len(c) - 1)], c[np.minimum(first + 2, len(c) - 1)]), triples))]
    border[at] = True
    cuts = np.flatnonzero(border)
    return _strings(place[cuts], data), np.diff(np.searchsorted(cuts, ends), prepend=0)


def _buffers(texts: pa.StringArray) -> tuple[np.ndarray, bytes]:
    """Offsets from 0 and the bytes of an array without nulls."""
    if not len(texts):
        return np.zeros(1, np.int64), b""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    return offsets - offsets[0], held[int(offsets[0]) : int(offsets[-1])].to_pybytes() if held else b""


def _strings(offsets: np.ndarray, data: bytes) -> pa.StringArray:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def cut_texts(texts: pa.StringArray, unit: re.Pattern) -> tuple[pa.StringArray, np.ndarray, list[int]]:
    """The units of all texts, their number by text, and each text's hash; as ``units`` does, on whole arrays."""
    texts = pc.fill_null(texts, "")
    spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise("", texts, " "))
    offsets, data = _buffers(spaced)
    view = memoryview(data)
    checks = [xxhash.xxh64_intdigest(view[a + 1 : b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    x = np.frombuffer(data, np.uint8)
    blank = (x == 32) | ((x >= 9) & (x <= 13))
    begins = blank.copy()  # white space begins a unit; another character only after white space that is no space
    begins[1:] |= ~blank[1:] & blank[:-1] & (x[:-1] != 32)
    may = np.flatnonzero(begins[1:]) + 1
    begins[may[_joined(unit)[x[may - 1], x[may]]]] = False
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.append(np.flatnonzero(begins), len(x))
    return _strings(at, data), np.diff(np.searchsorted(at, offsets)), checks


def units(text: str | None, unit: re.Pattern) -> list[str]:
    """The text, with a space in front, cut into units."""
    return unit.findall(" " + text) if text else []


def encode_units(distinct: DataFrame, pieces: Pieces) -> DataFrame:
    """Add ``ids`` to rows with a distinct ``unit`` each; further columns stay.

    Rows must be hash partitioned by ``unit``. They are grouped by their number as well, whose order
    is that of the exploded rows: the sort before the grouping finds them in order. Only a unit's
    last row carries the further columns.
    """
    others = [c for c in distinct.columns if c != "unit"]
    n = F.length("unit")
    cut = F.transform(
        F.sequence(F.lit(1), n),
        lambda s: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(pieces.longest), n - s + 1)),
            lambda k: F.struct((s - 1).alias("a"), (s - 1 + k).alias("b"), F.substring(F.col("unit"), s, k).alias("part")),
        ),
    )
    none = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit("").alias("part")))  # each unit has a row that matches
    edges = (
        distinct.withColumn("row", F.monotonically_increasing_id())
        .select("row", "unit", *others, F.inline(F.concat(F.flatten(cut), none)))
        .join(pieces.table(distinct.sparkSession), F.col("part") == F.col("piece"))
        .select("row", "unit", F.struct("a", "b", "score", "id").alias("edge"), *[F.when(F.col("b") == 0, F.col(c)).alias(c) for c in others])
        .groupBy("row", "unit")
        .agg(F.collect_list("edge").alias("edges"), *[F.first(c, ignorenulls=True).alias(c) for c in others])
    )

    def step(best, i):
        last = F.struct((F.element_at(best, i).score + pieces.fallback).alias("score"), (i - 1).alias("a"), F.lit(-1).alias("id"))
        into = F.filter("edges", lambda e: e.b == i)
        ways = F.transform(into, lambda e: F.struct((F.element_at(best, e.a + 1).score + e.score).alias("score"), e.a.alias("a"), e.id.alias("id")))
        return F.concat(best, F.array(F.array_max(F.concat(F.array(last), ways))))

    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("a"), F.lit(-1).alias("id")))
    best = F.aggregate(F.sequence(F.lit(1), n), start, step)
    walked = F.aggregate(
        F.sequence(n, F.lit(1), F.lit(-1)),
        F.struct(n.alias("at"), F.array().cast("array<struct<id:int,a:int>>").alias("path")),
        lambda w, i: F.when(
            w.at == i,
            F.struct(
                F.element_at(F.col("best"), i + 1).a.alias("at"),
                F.concat(F.array(F.struct(F.element_at(F.col("best"), i + 1).id.alias("id"), F.element_at(F.col("best"), i + 1).a.alias("a"))), w.path).alias("path"),
            ),
        ).otherwise(w),
    )
    byte_ids = F.array(*[F.lit(i) for i in pieces.byte_ids])

    def as_bytes(a):
        code = F.hex(F.encode(F.substring(F.col("unit"), a + 1, F.lit(1)), "UTF-8"))
        at = F.sequence(F.lit(1), F.length(code), F.lit(2))
        return F.transform(at, lambda i: F.element_at(byte_ids, F.conv(F.substring(code, i, F.lit(2)), 16, 10).cast("int") + 1))

    ids = F.flatten(F.transform("path", lambda p: F.when(p.id >= 0, F.array(p.id)).otherwise(as_bytes(p.a))))
    return edges.select("unit", *others, best.alias("best")).withColumn("path", walked.path).select("unit", *others, ids.alias("ids"))


_CHUNK = pa.schema([("chunk", pa.int64()), ("docs", pa.binary()), ("no_id", pa.binary()), ("lengths", pa.binary()), ("checks", pa.binary()), ("tokens", pa.binary()), ("parts", pa.binary()), ("counts", pa.binary()), ("vocabulary", pa.binary()), ("n_cells", pa.int32())])
_CHUNK_DDL = "chunk long, docs binary, no_id binary, lengths binary, checks binary, tokens binary, parts binary, counts binary, vocabulary binary, n_cells int"


def _pack(docs: DataFrame, pieces: Pieces) -> DataFrame:
    pattern, pairs, triples, longest, fallback = pieces.unit, pieces.pairs, pieces.triples, pieces.longest, pieces.fallback
    scores = docs.sparkSession.sparkContext.broadcast({t: s for t, _, s in pieces.rows})

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Rows of at most so many bytes of text together, or one row."""
        size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
        a = total = 0
        for i, n in enumerate(size.tolist()):
            if i > a and total + n > _SLICE_BYTES:
                yield batch.slice(a, i - a)
                a, total = i, 0
            total += n
        yield batch.slice(a)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, n = TaskContext.get().partitionId(), 0, [], 0
        unit = re.compile(pattern)

        def close() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in held])
            coded = pa.concat_arrays([h[1] for h in held]).dictionary_encode()
            blocks = [cells(coded.dictionary.slice(a, _BLOCK_UNITS), pairs, triples) for a in range(0, max(1, len(coded.dictionary)), _BLOCK_UNITS)]
            cut, counts = pa.concat_arrays([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])
            cut, counts = short_cells(cut, counts, scores.value, longest, fallback)
            cut = cut.dictionary_encode()
            order = pc.sort_indices(cut.dictionary).to_numpy()  # alike ones side by side compress better
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            offsets, data = _buffers(cut.dictionary.take(pa.array(order)))
            # a cell may hold any character: they are parted by their lengths
            sizes = squeeze(np.diff(offsets).astype(np.int32))
            vocabulary = len(sizes).to_bytes(8, "little") + sizes + squeeze(np.frombuffer(data, np.uint8))
            lengths, checks = (np.concatenate([h[i] for h in held]) for i in (2, 3))
            row = [chunk_id(part, number), pc.fill_null(ids, 0).to_numpy().tobytes(), ids.is_null().to_numpy(zero_copy_only=False).tobytes(), lengths.astype(np.int64).tobytes(), checks.tobytes(), squeeze(coded.indices.to_numpy()), squeeze(place[cut.indices.to_numpy()]), squeeze(counts.astype(np.int32)), vocabulary, len(order)]
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, _CHUNK, strict=True)], schema=_CHUNK)

        for batch in batches:
            for rows in slices(batch):
                if not rows.num_rows:
                    continue
                words, lengths, checks = cut_texts(rows["text"].cast(pa.string()), unit)
                held.append((rows["doc_id"].cast(pa.int64()), words, lengths, np.array(checks, np.uint64)))
                n += len(words)
                if n >= CHUNK_TOKENS:
                    yield close()
                    number, held, n = number + 1, [], 0
        if held:
            yield close()

    return docs.select("doc_id", "text").mapInArrow(pack, _CHUNK_DDL)


def use_of(chunk: int, at: int) -> int:
    if chunk >> (63 - CELL_BITS) or at >> CELL_BITS:
        raise OverflowError("too many tasks, or too many distinct cells in a chunk")
    return chunk << CELL_BITS | at


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct cell of a chunk."""
    for batch in batches:
        for chunk, vocabulary in zip(batch["chunk"].to_pylist(), batch["vocabulary"].to_pylist(), strict=True):
            n = int.from_bytes(vocabulary[:8], "little")
            sizes = expand(vocabulary[8 : 8 + n], np.int32)
            words = _strings(np.concatenate([[0], np.cumsum(sizes)]), expand(vocabulary[8 + n :], np.uint8).tobytes())
            use_of(chunk, len(words))
            for a in range(0, len(words), 50_000):
                part = words.slice(a, 50_000)
                yield pa.RecordBatch.from_pydict({"unit": part, "use": np.arange(a, a + len(part), dtype=np.int64) | use_of(chunk, 0)})


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, at, ids) to one packed row for each chunk and each so many rows."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        chunk, at = t["chunk"].to_numpy(), t["at"].to_numpy()
        ids = t["ids"].combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        sizes, order = np.diff(offsets), np.argsort(chunk, kind="stable")
        names, first = np.unique(chunk[order], return_index=True)
        rows: dict = {c: [] for c in ("chunk", "at", "sizes", "ids")}
        for name, part in zip(names.tolist(), np.split(order, first[1:]), strict=True):
            part = part[np.argsort(at[part])]
            rows["chunk"].append(name)
            rows["at"].append(squeeze(at[part].astype(np.int32)))
            rows["sizes"].append(squeeze(sizes[part].astype(np.int32)))
            rows["ids"].append(squeeze(_take(flat, offsets[:-1][part], sizes[part]).astype(np.int32)))
        return pa.RecordBatch.from_pydict(rows, schema=pa.schema([("chunk", pa.int64()), ("at", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())]))

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= _PACK_ROWS:
            yield packed(held)
            held, n = [], 0
    if n:
        yield packed(held)


def _take(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``start``, one after the other."""
    if not len(size):
        return flat[:0]
    ends = np.cumsum(size)
    kind = np.int32 if max(len(flat), ends[-1]) < 1 << 31 else np.int64  # the index is the largest array of a chunk
    index = np.repeat((start - (ends - size)).astype(kind), size)
    index += np.arange(ends[-1], dtype=kind)
    return flat[index]


_RESULT = "doc_id long, n_units long, n_pieces long, ids array<int>, round_trip boolean"


def encode_documents(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_units, n_pieces, ids, round_trip (do the ids decode to the text?)."""
    pieces = Pieces(model_file or default_model())
    data = docs.sparkSession.sparkContext.broadcast(pieces.data)
    chunks = _pack(docs, pieces).repartition("chunk")
    # A unit's lattice takes tens of times the unit's space: partitions are that much smaller than usual.
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        chunks.mapInArrow(_listed, "unit string, use long")
        .repartition(parts, "unit")
        .groupBy("unit")
        .agg(F.collect_list("use").alias("uses"))
    )
    use = F.col("use")
    answers = (
        encode_units(found, pieces)
        .select(F.explode("uses").alias("use"), "ids")
        .select(F.shiftright(use, CELL_BITS).alias("chunk"), use.bitwiseAND(F.lit((1 << CELL_BITS) - 1)).cast("int").alias("at"), "ids")
        .mapInArrow(_gathered, "chunk long, at binary, sizes binary, ids binary")
    )

    def assemble(one: pa.Table, got: pa.Table) -> pa.Table:
        row = one.to_pylist()[0]
        at = np.concatenate([expand(x, np.int32) for x in got["at"].to_pylist()] or [np.empty(0, np.int32)])
        sizes = np.concatenate([expand(x, np.int32) for x in got["sizes"].to_pylist()] or [np.empty(0, np.int32)]).astype(np.int64)
        flat = np.concatenate([expand(x, np.int32) for x in got["ids"].to_pylist()] or [np.empty(0, np.int32)])
        start, size = np.zeros(row["n_cells"], np.int64), np.full(row["n_cells"], -1, np.int64)
        start[at], size[at] = np.cumsum(sizes) - sizes, sizes
        if (size < 0).any():
            raise ValueError("a chunk and its answers differ")
        # the ids of the distinct units, from those of their cells
        parts, counts = expand(row["parts"], np.int32), expand(row["counts"], np.int32)
        flat, upto = _take(flat, start[parts], size[parts]), np.concatenate([[0], np.cumsum(size[parts])])
        cut = upto[np.concatenate([[0], np.cumsum(counts)])]
        start, size = cut[:-1], np.diff(cut)
        tokens, lengths = expand(row["tokens"], np.int32), np.frombuffer(row["lengths"], np.int64)
        ids = _take(flat, start[tokens], size[tokens])
        upto = np.concatenate([[0], np.cumsum(size[tokens])])
        cut = upto[np.concatenate([[0], np.cumsum(lengths)])]
        no_id, doc = np.frombuffer(row["no_id"], bool), np.frombuffer(row["docs"], np.int64)
        checks = np.frombuffer(row["checks"], np.uint64).tolist()
        same = [xxhash.xxh64_intdigest(_bytes(ids[a:b], data.value)) == c for a, b, c in zip(cut[:-1].tolist(), cut[1:].tolist(), checks, strict=True)]
        return pa.table({
            "doc_id": pa.array(doc, mask=no_id), "n_units": lengths, "n_pieces": np.diff(cut),
            "ids": pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids, pa.int32())), "round_trip": same,
        })

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(assemble, _RESULT)


def _bytes(ids: np.ndarray, data: list[bytes]) -> bytes:
    return b"".join([data[i] for i in ids.tolist()])[1:]


def decode_documents(encoded: DataFrame, model_file: str | None = None) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; unknown ids decode to nothing."""
    data = encoded.sparkSession.sparkContext.broadcast(Pieces(model_file or default_model()).data)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = data.value
            texts = [b"".join([known[i] for i in ids or [] if i is not None and 0 <= i < len(known)])[1:].decode("utf-8", "replace") for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")
